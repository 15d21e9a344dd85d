"""DataFrame operators: layout extraction, routing, alignment, pairs, links, listings."""
