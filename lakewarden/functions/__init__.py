"""Column expressions: everything here is Column -> Column and stays inside codegen."""
