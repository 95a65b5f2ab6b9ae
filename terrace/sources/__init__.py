"""Readers: source specification in, raw DataFrame out."""
