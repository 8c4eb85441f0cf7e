"""Plain single-machine versions that the tests compare with."""

import base64
import hashlib
import re
import struct
import zlib

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"


def rows(name, sf=SF):
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


def license_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
                       re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    starts, labels = [], set()
    for phrase, label in (("under the mit license", "mit"), ("apache license version 2", "apache-2"),
                          ("cc by nc", "cc-by-nc")):
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def pii_base(text):
    text, found = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            found.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"\D", "", m[0])
        odd = sum(int(c) for c in d[::-1][::2])
        even = sum(sum(map(int, str(2 * int(c)))) for c in d[::-1][1::2])
        if 12 <= len(d) <= 19 and (odd + even) % 10 == 0:
            found.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub(r"\D", "", m[0])) <= 15:
            found.append((m.start(), 3, "phone", m.end()))
    return [(a, k, b) for a, _, k, b in sorted(found)]


def rule_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i:i + 5]), []).append(i)
    repeated = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(repeated), failed)


def warc(pages):
    digest = {}
    for p in pages:
        data = (p["html"] or "").encode()
        p["d"] = base64.b32encode(hashlib.sha1(data).digest()).decode()
        p["n"] = len(data)
        digest[p["d"]] = min(digest.get(p["d"], p["page_id"]), p["page_id"])
    return {p["page_id"]: (p["n"], p["d"], "response" if digest[p["d"]] == p["page_id"] else "revisit",
                           None if digest[p["d"]] == p["page_id"] else digest[p["d"]]) for p in pages}


def ids(library, text, end=2):
    x = library.encode(text or "", add_special_tokens=False).ids + [end]
    return x, struct.pack(f"<{len(x)}I", *x)


def crc(x):
    return zlib.crc32(struct.pack(f"<{len(x)}I", *x))


def gram_set(text, n=5):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    if not words:
        return frozenset()
    if len(words) < n:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1))


def smith_waterman(a, b, match=2, mismatch=-1, gap=-1):
    last, best = [0] * (len(b) + 1), 0
    for x in a:
        here = [0]
        for j, y in enumerate(b, 1):
            here.append(max(0, last[j - 1] + (match if x == y else mismatch), last[j] + gap, here[j - 1] + gap))
        best, last = max(best, *here), here
    return best
