import os
import sys

# Helpers of these tests, and those of the tests one folder up.
sys.path[:0] = [os.path.dirname(os.path.abspath(__file__)), os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]
