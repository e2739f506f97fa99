"""Plans: transform/load jobs, the star, the analytical queries, scenario and extra reports."""
