"""Column expressions: native, code-generated, no Python workers."""
