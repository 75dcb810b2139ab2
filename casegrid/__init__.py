"""Evidence adjudication over document packets, as Spark plans."""
