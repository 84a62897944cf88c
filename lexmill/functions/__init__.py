"""lexmill.functions"""
