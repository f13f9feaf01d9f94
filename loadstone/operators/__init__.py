"""Schema, inference, quality and row assembly over DataFrames."""
