"""Scans, the fixture adapter, codelist catalogue and stored tables."""
