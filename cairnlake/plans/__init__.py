"""Table recipes composed from the operators: silver, dimensions, facts, checks."""
