"""Raster time series as Spark tables: cubes, masks, composites, features, grids, classification."""
