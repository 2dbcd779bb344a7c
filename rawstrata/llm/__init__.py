"""Operators for preparing training text, each with its registered query.

``registry`` gathers the queries and their SQL; nothing outside this folder imports it
but the driver's entry file.
"""
