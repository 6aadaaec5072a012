"""Plans: marts, serving queries, batch runs, publication."""
