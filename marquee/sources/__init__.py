"""Readers and writers: raw dumps, envelopes, source manifests, curated layouts."""
