"""The flat event table, the marts, the model features and the scoring, as DataFrames."""
