"""Plan shapes shared by the operators: skew-safe group facts, chunked order, written tables."""
