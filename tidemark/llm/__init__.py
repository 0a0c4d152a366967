"""Operators for texts: encoding, mixing sources, template residue. Nothing else in tidemark imports this package."""
