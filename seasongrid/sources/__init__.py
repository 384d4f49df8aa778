"""Reading landed JSON and tables, and writing them."""
