"""Relational building blocks shared by the table builders and measures."""
