"""Reading inputs, the table store, and exports."""
