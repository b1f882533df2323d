"""Where rows go: raw batches, trusted datasets, keyed tables and the catalog."""
