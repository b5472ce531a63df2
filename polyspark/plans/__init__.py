"""The three end-to-end jobs: evaluation, corpus preparation, vocabulary extension."""
