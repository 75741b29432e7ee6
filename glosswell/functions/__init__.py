"""Column expressions shared by the jobs. All are built-ins: no Python runs per row."""
