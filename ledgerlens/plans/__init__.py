"""Report plans: one function per report step, (tables, parameters) -> DataFrame."""
