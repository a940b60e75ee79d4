"""tertulia - topic mining over collections of social-media posts, on PySpark DataFrames."""

__version__ = "0.1.0"
