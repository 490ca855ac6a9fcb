"""Point-in-time safe analytics as lazy Spark plans."""
