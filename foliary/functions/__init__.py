"""Column functions: everything here is built-in expressions that Catalyst can plan."""
