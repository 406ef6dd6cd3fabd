"""Spark analytics over product reviews and user-behaviour logs."""
