"""DataFrame operators: ``df.transform(operator, ...)``."""
