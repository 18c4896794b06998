"""Plans: training, scoring, and the registered queries, built from the operators."""
