"""Statistical grids, rasters, road networks and corpora as Spark DataFrames."""
