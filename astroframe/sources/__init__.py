"""Sources and sinks: table loading, fixture views, catalogue I/O."""
