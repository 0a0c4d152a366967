"""functions of tidemark."""
