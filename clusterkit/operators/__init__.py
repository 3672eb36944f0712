"""Fit / transform pairs over DataFrames. A fit returns model-sized values; a transform is lazy."""
