"""Fixed values. They must match the public feed and the stored data exactly."""

# Feed collection identifier of each tracked activity.
COLLECTION_BY_KIND = {
    "post": "app.bsky.feed.post",
    "like": "app.bsky.feed.like",
    "repost": "app.bsky.feed.repost",
    "follow": "app.bsky.graph.follow",
    "block": "app.bsky.graph.block",
    "profile_update": "app.bsky.actor.profile",
}
ENTITY_BY_KIND = {
    "post": "posts",
    "like": "likes",
    "repost": "reposts",
    "follow": "follows",
    "block": "blocks",
    "profile_update": "profile_updates",
}
FEED_OPERATIONS = ("create", "update", "delete")
RECORD_URI_PREFIX = "at://"
EMBED_EXTERNAL = "app.bsky.embed.external"
EMBED_IMAGES = "app.bsky.embed.images"
EMBED_VIDEO = "app.bsky.embed.video"

# Change-data-capture vocabulary.
ENTITIES = ("users", "posts", "likes", "reposts", "follows", "blocks", "profile_updates")
ACTIVITY_ENTITIES = ("posts", "likes", "reposts", "follows", "blocks")
CHANGE_OPERATIONS = ("c", "u", "d", "r")

# Reasons written to quarantine.
REASON_UNPARSEABLE = "unparseable message: invalid JSON"
REASON_UNKNOWN_ENTITY = "unknown event type: "
REASON_UNKNOWN_OPERATION = "unknown operation: "
REASON_MISSING_FIELD = "missing required field: "
REASON_FUTURE = "timestamp too far in the future"
REASON_PAST = "timestamp too far in the past"

SEGMENTS = ("creator", "engager", "lurker")
INTERACTIONS = ("like", "repost", "follow", "block")
REASON_FOLLOW_RATE = "high follow rate"
REASON_LIKE_RATE = "high like rate"

CALENDAR_START = "2024-01-01"
CALENDAR_END = "2030-12-31"
