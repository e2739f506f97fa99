"""DataFrame operators: clean, enrich, dimensions, warehouse loads, quality, ranking, percentiles."""
