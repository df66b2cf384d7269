"""Views and cleansing jobs: from raw tables to served and staging tables."""
