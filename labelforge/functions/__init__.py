"""Column expressions: text normalisers, tokens, HTML fragments."""
