"""End-to-end jobs over layers. Each takes paths and returns the layers it wrote."""
