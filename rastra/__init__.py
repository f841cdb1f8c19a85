"""rastra: geospatial raster and vector analytics as Spark plans."""
