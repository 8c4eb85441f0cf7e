"""Licences (1), personal data (7), quality rules (10), languages (9)."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from revlens.llm import language, license, pii, rules
from tests.llm import brute

TEXTS = [None, "", " \n\t", "a", "a b c d e f g h i j " * 30, "x" * 50_000, "1" * 30_000, "Ünï ßé 日本 word", "é" * 9 + " a",
         "a b\na b\n\na b\n c", "MIT license under the mit license!", "to be or not to be to be or not to be"]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empties, long texts, repeated rows, and columns that clash with the results' names."""
    data = [(k, t, None, None, 1, "z") for k, t in enumerate(TEXTS)] + [(1, "", None, None, 1, "z"), (None, "a b", "en", "s", 2, "z")]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, kept int, row string")


def check_odd(df, n, id_col="doc_id"):
    rows = df.collect()
    assert len(rows) == n
    return {r[id_col]: r for r in rows}


def test_license_base_matches_brute_force(spark):
    want = {r["doc_id"]: brute.license_base(r["text"]) for r in brute.rows("documents")}
    got = entry.queries()["op1_license_templates"](spark, brute.SF).collect()
    assert len(got) == len(want)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want[r.doc_id]
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1


def test_license_markup():
    t = (("x", "alpha <<beginOptional>>one two<<beginOptional>>three<<endOptional>><<endOptional>> beta "
               "<<var;words=1-2>> gamma"),)
    ends = {"alpha beta v gamma": 4, "alpha one two beta v w gamma": 7, "alpha one two three beta v gamma": 7,
            "alpha one beta v gamma": -1, "alpha beta gamma": -1, "alpha beta a b c gamma": -1, "alpha beta v": -1}
    for text, end in ends.items():
        _, _, places = license.scan(text, t, ())
        assert places == ([(0, end, "x")] if end > 0 else []), text
    with pytest.raises(ValueError):
        license.Automaton("a <<beginOptional>> b")
    with pytest.raises(ValueError):
        license.Automaton("<<var;words=1-2>> b")


def test_license_whole_texts():
    _, base, places = license.scan("Foo. This work is licensed under the GNU General Public License, version 3. Bar")
    assert not base and [x for _, _, x in places] == ["gpl-3"]
    _, base, places = license.scan('Permission is hereby granted, free of charge, to any person obtaining a copy of this software '
                                   'and associated documentation files (the "Software"), to deal in the Software without '
                                   'restriction, including without limitation the rights to use, copy, modify, merge, publish, '
                                   'distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the '
                                   'Software is furnished to do so, subject to the following conditions: The above copyright notice '
                                   'and this permission notice shall be included in all copies or substantial portions of the Software.')
    assert {x for _, _, x in places} == {"mit"} and not base


WHOLE = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
        (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
        subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
        BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
        AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
        OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
        disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
        disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor
        the names of its contributors may be used to endorse or promote products derived from this software without specific prior written
        permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
        INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO
        EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
        DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
        INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
        OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
        that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR
        DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL
        THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE,
        DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
        PERFORMANCE OF THIS SOFTWARE.""",
}


@pytest.mark.parametrize("label", sorted(WHOLE))
def test_license_covers_whole_wordings(label):
    words, _, placed = license.scan("before it " + WHOLE[label] + " after it")
    assert [(a, b) for a, b, x in placed if x == label] == [(2, len(words) - 2)]
    changed = license.scan("before it " + " ".join(WHOLE[label].split()).replace("IN NO EVENT", "IN SOME EVENT") + " after it")[2]
    assert all(b < len(words) - 20 for _, b, x in changed if x == label)  # the changed disclaimer is not covered


def test_license_spellings():
    assert [x for *_, x in license.scan("This is licenced under the terms of the MIT licence now")[2]] == ["mit"]
    assert license.scan("under the MIT licence")[1] == []  # the base phrase is exact
    assert [x for *_, x in license.scan("© 2020 Some Company. All rights reserved.")[2]] == ["all-rights-reserved"]


def test_license_odd(odd):
    got = check_odd(license.license_scan(odd), len(TEXTS) + 2)
    assert got[10].n_base == 1 and got[0].n_words == 0 and got[0].score == 0.0


def test_pii_base_matches_brute_force(spark):
    got = entry.queries()["op7_pii_deobfuscation"](spark, brute.SF).collect()
    want = {r["doc_id"]: brute.pii_base(r["text"]) for r in brute.rows("documents")}
    assert len(got) == len(want)
    for r in got:
        spans = want[r.doc_id]
        joined = ",".join(f"{k}:{a}:{b}" for a, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[1] == k for s in spans) for k in pii.KINDS)
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a1 2.-+@(9é%\n0", max_size=60))
def test_pii_detectors_equal_the_patterns(text):
    assert sorted(pii.detect(text), key=pii._order) == brute.pii_base(text)


@pytest.mark.parametrize("text,kind,want", [
    ("mail john.doe [at] example [dot] com now", "email", "john.doe [at] example [dot] com"),
    ("mail john (dot) doe(at)example(dot)co(dot)uk now", "email", "john (dot) doe(at)example(dot)co(dot)uk"),
    ("reach me: jane at example dot org, ok", "email", "jane at example dot org"),
    ("jаne@exаmple.com!", "email", "jаne@exаmple.com"),
    ("jane＠example．com", "email", "jane＠example．com"),
    ("ip １９２.168.0.１ up", "ip", "１９２.168.0.１"),
    ("call plus one five five five one two three four five six seven now", "phone",
     "plus one five five five one two three four five six seven"),
    ("card four one one one one one one one one one one one one one one one end", "card",
     "four one one one one one one one one one one one one one one one"),
    ("x jane@exam​ple.com", "email", "jane@exam​ple.com"),
    ("plus one (five five five) one two three - four five six seven, ok", "phone", "plus one (five five five) one two three - four five six seven"),
    ("plus four four\ntwo zero seven nine four six\nzero nine five eight", "phone", "plus four four\ntwo zero seven nine four six\nzero nine five eight"),
    ("write to a_b @ host.org today", "email", "a_b @ host.org"),
    ("jane_at_example_dot_com", "email", "jane_at_example_dot_com"),
    ("ask jane at example dot co dot uk dot thanks", "email", "jane at example dot co dot uk"),
    ("first x [at] y [dot] de, then jo (at) ho (dot) fr", "email", "jo (at) ho (dot) fr"),
])
def test_pii_disguises(text, kind, want):
    base, every = pii.spans_of(text)
    assert any(k == kind and text[a:b] == want for a, k, b in every), every
    assert f"[{kind.upper()}]" in pii.masked(text, every)


@pytest.mark.parametrize("text", [
    "look at example.com for more", "one two three testing", "we met at noon", "a [at] b", "three dot four",
    "Éai les, oution. Èle ouchan", "dot com at home", "meet me at foo dot bar", "see @ home.com dot org", "3 @ 2.5 kg", "one two threefold four",
    "updated_at_table.column", "rows [at] 3 [dot] 5"])
def test_pii_leaves_clean_texts(text):
    assert pii.spans_of(text) == ([], [])


@pytest.mark.parametrize("part", [
    "a dot ", "a_dot_b@", "[at] a dot ", "x [at] y [dot] com ", "one ", "one two three four five, ", "one two three fourx ", " ", "  at  ", "at @ . ",
    "a at b dot com ", "jane@x.org ", "+1 (2) ", "1-", "４ ", "_at_", "_dot_", "( at ) ", "(one) "])
def test_pii_time_grows_with_the_text(part):
    import time
    took = []
    for n in (25_000, 100_000, 400_000):  # a quadratic scan takes 16 times as long for 4 times the text
        began = time.process_time()
        pii.spans_of("[at] " + part * (n // len(part)))
        took.append(time.process_time() - began)
        if n > 25_000:
            assert took[-1] < 0.2 + 9 * took[-2]


def test_pii_odd(odd):
    got = check_odd(pii.find_pii(odd, with_text=True), len(TEXTS) + 2)
    assert got[0].masked_text is None and got[0].spans == ""
    masked = pii.mask_documents(odd.withColumn("text", odd.text)).collect()
    assert len(masked) == len(TEXTS) + 2 and masked[0].kept == 1


def test_rules_match_brute_force(spark):
    got = entry.queries()["op10_rule_ledger"](spark, brute.SF).collect()
    want = {r["doc_id"]: brute.rule_base(r["text"]) for r in brute.rows("documents")}
    assert len(got) == len(want)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want[r.doc_id]
        assert not (r.kept and r.base_failed)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=40))
def test_repeated_windows(words):
    assert rules.repeated_window_words(words) == brute.rule_base(" ".join(words))[4]


def test_repeated_windows_with_many_words():
    words = [f"w{k}" for k in range(70_000)] * 2
    assert rules.repeated_window_words(words) == 140_000
    assert rules.repeated_window_words(words[:70_004]) == 0
    assert rules.repeated_window_words(words[:70_005]) == 10


def test_ledger_policies_and_ablations(spark, odd):
    led = rules.ledger(odd)
    got = check_odd(rules.apply_policy(led, "base-1"), len(TEXTS) + 2)
    assert not got[0].kept and not got[4].kept
    abl = {r.rule: r for r in rules.ablations(led, "base-1").collect()}
    docs = rules.apply_policy(led, "base-1").collect()
    for name in rules.POLICIES["base-1"].rules:
        others = rules.POLICIES["base-1"].mask & ~rules.BIT[name]
        assert abl[name].n_kept_without == sum(r.fail_mask & others == 0 for r in docs)
        assert abl[name].n_failed == sum(r.fail_mask & rules.BIT[name] != 0 for r in docs)
    assert rules.ablations(led.limit(0), "base-1").count() == 0


def test_rules_leave_good_documents(spark):
    got = {r.doc_id: r.kept for r in entry.queries()["op10_rule_ledger"](spark, "/root/testdata/sf0.01").collect()}
    good = [r["doc_id"] for r in brute.rows("labels", "/root/testdata/sf0.01") if r["quality"] == 1]
    base = {r["doc_id"]: brute.rule_base(r["text"])[5] for r in brute.rows("documents", "/root/testdata/sf0.01")}
    assert all(got[d] for d in good if not base[d])


def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = entry.queries()["op9_language_hypervectors"](spark, sf).collect()
    lang = {r["doc_id"]: r["lang"] for r in brute.rows("documents", sf)}
    import zlib
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_bundles_as_defined():
    import numpy as np
    b = language.Bundler(256)
    codes = b.codes("Ab, a")
    assert [chr(c >> 42) + chr((c >> 21) & 0x1FFFFF) + chr(c & 0x1FFFFF) for c in codes] == [" ab", "ab ", "b a", " a "]
    v = {c: language.letter_vectors(np.array([ord(c)]), 256)[0].astype(int) for c in " ab"}
    want = sum(np.roll(v[x], 2) * np.roll(v[y], 1) * v[z] for x, y, z in (" ab", "ab ", "b a", " a "))
    assert (b.bundles([codes], np.array([0]), 1) == want).all()
    assert b.codes(None) is None and b.codes("12 !") is None


def _plain_profile(texts, dimensions):
    """Sum of the bound trigram vectors of some texts, letter by letter."""
    import re

    import numpy as np
    total, vector = np.zeros(dimensions), {}
    for t in texts:
        words = re.sub(r"[\W\d_]+", " ", (t or "").lower()).strip()
        padded = f" {words} " if words else ""
        for a, b, c in zip(padded, padded[1:], padded[2:]):
            if a + b + c not in vector:
                x, y, z = (language.letter_vectors(np.array([ord(k)]), dimensions)[0].astype(int) for k in (a, b, c))
                vector[a + b + c] = np.roll(x, 2) * np.roll(y, 1) * z
            total += vector[a + b + c]
    return total


def test_language_query_equals_plain_profiles(spark, monkeypatch):
    """The whole query again: prototypes and cosines from plain sums, also over many small slices."""
    import zlib

    import numpy as np
    docs = [r for r in brute.rows("documents") if len(r["text"] or "") < 3_000]
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in docs}
    langs = sorted({r["lang"] for r in docs if r["lang"] is not None and not held[r["doc_id"]]})
    profiles = [_plain_profile([r["text"] for r in docs if r["lang"] == x and not held[r["doc_id"]]], language.DIMENSIONS) for x in langs]
    profiles = [p / np.linalg.norm(p) for p in profiles]
    schema = "doc_id long, text string, lang string"
    df = spark.createDataFrame([(r["doc_id"], r["text"], r["lang"]) for r in docs], schema)
    for step, size in ((400_000, 4_096), (1_000, 50)):
        monkeypatch.setattr(language, "STEP_CHARS", step)
        monkeypatch.setattr(language, "SLICE_TRIGRAMS", size)
        got = {r.doc_id: r for r in language.identify(df, language.train(df.filter(~language.held_out()))).collect()}
        for r in docs[::5]:
            own = _plain_profile([r["text"]], language.DIMENSIONS)
            if not own.any():
                continue
            cosine = [float(own @ p / np.linalg.norm(own)) for p in profiles]
            assert got[r["doc_id"]].score == pytest.approx(max(0.0, max(cosine)), abs=1e-4)
            assert cosine[langs.index(got[r["doc_id"]].lang_pred)] > max(cosine) - 1e-4


def test_language_memory_is_bounded():
    """A million different-looking letters in one text: sums are made slice by slice."""
    import time
    import tracemalloc

    import numpy as np
    r = np.random.default_rng(2)
    text = "".join(map(chr, r.integers(0x4E00, 0x9FA5, 300_000)))
    b = language.Bundler()
    codes = b.codes(text)
    tracemalloc.start()
    began = time.process_time()
    bundle = b.bundles([codes], np.array([0]), 1)
    assert tracemalloc.get_traced_memory()[1] < 300e6 and time.process_time() - began < 60
    tracemalloc.stop()
    half = len(codes) // 2
    assert (bundle == b.bundles([codes[:half]], np.array([0]), 1) + b.bundles([codes[half:]], np.array([0]), 1)).all()


def test_language_odd(spark, odd):
    none = language.train(odd.filter("lang = 'xx'"))
    assert {r.lang_pred for r in language.identify(odd, none).collect()} == {"und"}
    some = language.train(odd)
    got = check_odd(language.identify(odd, some), len(TEXTS) + 2)
    assert got[0].lang_pred == "und" and got[6].lang_pred == "und" and got[3].lang_pred == "en"
    assert language.identify(odd.limit(0), some).count() == 0
