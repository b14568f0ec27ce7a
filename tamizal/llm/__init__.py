"""Text operators for corpora; nothing else in the package imports them."""
