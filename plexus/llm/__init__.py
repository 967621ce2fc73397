"""Operators of a training-data pipeline: token files, near duplicates,
fingerprints, secret scans, toxicity, language-model scores, vector search,
source mixing, packing and web archives.  Nothing outside this subpackage
imports it."""
