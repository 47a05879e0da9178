"""wayfold.sources"""
