"""SQL expressions for lengths, padding and CSV text.

They are composed as text: a wide table needs thousands of them, and Spark
parses text much faster than Python can build as many column objects.
"""
