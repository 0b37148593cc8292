"""Live input: runners, sinks, kept state, and the jobs as streaming queries."""
