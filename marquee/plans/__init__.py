"""Questions answered by composing the operators."""
