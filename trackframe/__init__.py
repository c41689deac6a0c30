"""trackframe: keypoint time-series and label-set analytics on Spark DataFrames."""
