"""textsieve: corpus analytics as Spark DataFrame / Column operators."""

__version__ = "0.1.0"
