"""Code-context graph analytics and corpus preparation on PySpark."""
