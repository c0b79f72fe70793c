"""labeltext: labelled-text analytics as plain functions over Spark DataFrames."""
