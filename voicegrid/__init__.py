"""Text-augmentation engine on Spark DataFrames: read, clean, fan out, rewrite, schedule, repair, merge and profile short posts."""
