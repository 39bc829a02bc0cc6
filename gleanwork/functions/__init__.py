"""Column functions. `sql.register_sql` offers the main ones to `spark.sql`."""
