"""Operators that turn raw text into training data; nothing else in the package imports them."""
