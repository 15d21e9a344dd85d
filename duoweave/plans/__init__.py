"""Plans: fixture views over the test tables, end-to-end corpus plans, query catalog."""
