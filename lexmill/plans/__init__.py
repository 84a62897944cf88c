"""lexmill.plans"""
