"""lexmill.sources"""
