"""The model layers (staging, facts, marts), the views and reports on them, and the layer runner."""
