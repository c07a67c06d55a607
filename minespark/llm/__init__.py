"""Operators for text corpora: encoding, packing and shared spans."""
