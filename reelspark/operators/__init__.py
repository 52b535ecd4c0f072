"""DataFrame operators: quality, drift, cleaning, scoring, retrieval."""
