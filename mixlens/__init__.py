"""mixlens: advertising analytics and marketing-mix modelling as Spark DataFrame jobs."""
