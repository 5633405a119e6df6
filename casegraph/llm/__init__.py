"""Operators for preparing training text: documents in, decisions, spans, tokens or files out."""
