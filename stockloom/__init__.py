"""Fulfilment-centre analytics and stock rules as Spark DataFrame jobs."""
