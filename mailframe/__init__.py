"""mailframe: mail analytics and mailbox synchronisation as Spark DataFrame plans."""

__version__ = "0.1.0"
