"""Column expressions.  Everything here returns a ``pyspark.sql.Column`` that
stays inside whole-stage codegen (no Python UDFs)."""
