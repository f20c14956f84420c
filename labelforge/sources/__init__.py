"""Readers and writers: header CSV, JSON payloads, XML entries, model parameters."""
