"""Operators for text corpora: token ids, packing into containers, one form for texts that look alike."""
