"""Tests of tillroll.llm."""
