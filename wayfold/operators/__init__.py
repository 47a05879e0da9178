"""wayfold.operators"""
