"""plans of tidemark."""
