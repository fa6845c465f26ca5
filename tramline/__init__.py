"""Analytics for public transport in real time, and for training corpora, on Spark."""
