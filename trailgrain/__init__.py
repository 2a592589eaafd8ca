"""trailgrain: faceted-collection and web-harvest analytics on Spark."""

__version__ = "0.1.0"
