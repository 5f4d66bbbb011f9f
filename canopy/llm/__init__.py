"""Operators for preparing training text: dedup, language, chat, URLs, tokens, fingerprints, vectors, mixing."""
