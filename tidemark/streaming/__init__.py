"""streaming of tidemark."""
