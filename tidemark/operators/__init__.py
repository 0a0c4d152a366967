"""operators of tidemark."""
