"""Training-data operators over document, page and conversation tables (nothing else in the package imports this)."""
