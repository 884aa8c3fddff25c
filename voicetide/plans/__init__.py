"""End-to-end plans: landed items to posts, posts to classes, classes to reports."""
