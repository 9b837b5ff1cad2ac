"""Forest, climate, carbon and wildlife analytics as Spark DataFrame transformations."""
