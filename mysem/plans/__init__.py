"""Jobs made of several operators: data movement, validation and profiles."""
