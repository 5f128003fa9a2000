"""Sources: landed payload readers and the test-table binding."""
