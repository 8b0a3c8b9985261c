"""Named queries over the driver's tables, each next to its independent SQL form."""
