"""Column functions: keys, time, tiers and geometry. All are expressions that Catalyst compiles; none is a Python UDF."""
