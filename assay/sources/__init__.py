"""Landing files, named tables, and the landing view of the supplied test tables."""
