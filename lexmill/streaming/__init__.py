"""lexmill.streaming"""
