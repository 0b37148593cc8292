"""Analytics on access logs, short posts and numeric streams, as Spark jobs.

``functions``  column expressions (parsing, tokenising, vectors)
``sources``    readers for stored and streamed input, and derived inputs
``operators``  DataFrame -> DataFrame building blocks
``plans``      whole batch jobs made of operators
``streaming``  sinks, runners and stateful processors for live input
"""
