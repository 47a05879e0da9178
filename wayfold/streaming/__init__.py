"""wayfold.streaming"""
