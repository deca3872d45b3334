"""Batch analytics for reward games and support chats on Spark DataFrames."""
