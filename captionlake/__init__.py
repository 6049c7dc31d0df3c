"""captionlake: analytics over transcript archives as PySpark DataFrames."""
