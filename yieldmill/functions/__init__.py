"""Column functions: production time, text and number helpers, process control."""
