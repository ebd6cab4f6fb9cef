"""cohortscore: building and judging binary risk models on Spark DataFrames."""
