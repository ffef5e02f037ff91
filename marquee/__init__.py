"""marquee: a Spark-native engine for theatre-licence listings and the text around them.

Every public operator is a pure ``DataFrame -> DataFrame`` function. Nothing in the
core imports the optional ``llm`` subpackage.
"""

__version__ = "0.1.0"
