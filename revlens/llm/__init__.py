"""Operators of a training-data pipeline: licences, archives, token files,
near copies, decontamination, quality, personal data, packing, languages."""
