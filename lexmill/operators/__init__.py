"""lexmill.operators"""
