"""Column expressions: everything here stays inside Catalyst unless its docstring says otherwise."""
