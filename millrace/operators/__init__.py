"""DataFrame operators shared by the landing and cleansing jobs."""
