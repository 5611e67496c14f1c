"""Finding, governing and masking personal data in warehouse tables, on Spark."""

__version__ = "0.1.0"
