"""ParcelSpark: privacy-preserving property-price analytics as Spark jobs."""
