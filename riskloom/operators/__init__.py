"""DataFrame to DataFrame steps, for use with ``df.transform``."""
