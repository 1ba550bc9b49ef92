"""Speech and text corpus preparation on Spark: DataFrame in, DataFrame out."""
