"""Plans: public run_* compositions and the registry of checked queries."""
