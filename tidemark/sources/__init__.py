"""sources of tidemark."""
