"""geolake: point clouds, elevation rasters and metadata catalogs as Spark DataFrames."""

__version__ = "0.1.0"
