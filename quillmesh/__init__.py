"""quillmesh: set-at-a-time analysis of very long text contexts on Spark."""

__version__ = "0.1.0"
