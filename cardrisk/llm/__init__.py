"""Training-data operators over the ``documents`` table (nothing else in the library imports this)."""
