"""Jobs over whole tables: DataFrames in, DataFrame out."""
