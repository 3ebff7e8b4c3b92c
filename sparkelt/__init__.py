"""sparkelt: near-real-time ELT and dimensional modelling on PySpark."""
