"""The text formats of the rendered documents, byte for byte."""

IMPORT_HEADER = """<?xml version="1.0" encoding="UTF-8"?>
<rss version="2.0"
    xmlns:excerpt="http://wordpress.org/export/1.2/excerpt/"
    xmlns:content="http://purl.org/rss/1.0/modules/content/"
    xmlns:wfw="http://wellformedweb.org/CommentAPI/"
    xmlns:dc="http://purl.org/dc/elements/1.1/"
    xmlns:wp="http://wordpress.org/export/1.2/">

  <channel>

    <language>en-US</language>
    <wp:wxr_version>1.2</wp:wxr_version>


"""

IMPORT_FOOTER = """
  </channel>
</rss>

"""

POST_ITEM = """      <item>
        <title>{title}</title>
        <pubDate>{pub_date}</pubDate>
        <wp:post_id>{post_id}</wp:post_id>
        <description></description>\x20
        <content:encoded><![CDATA[{captions}{body}
{permalink}
]]></content:encoded>
        <excerpt:encoded><![CDATA[]]></excerpt:encoded>
        <dc:creator><![CDATA[{author}]]></dc:creator>
        <wp:post_date>{post_date}</wp:post_date>
        <wp:post_date_gmt>{post_date}</wp:post_date_gmt>
        <wp:comment_status>closed</wp:comment_status>
        <wp:ping_status>open</wp:ping_status>
        <wp:post_name>{slug}</wp:post_name>
        <wp:status>publish</wp:status>
        <wp:post_parent>0</wp:post_parent>
        <wp:menu_order>0</wp:menu_order>
        <wp:post_type>post</wp:post_type>
        <wp:post_password></wp:post_password>
        <wp:is_sticky>0</wp:is_sticky>

{categories}{metadata}      </item>


"""

POST_CATEGORY = """        <category domain="category" nicename="{nicename}"><![CDATA[{name}]]></category>
"""

POST_METADATA = """        <wp:postmeta>
            <wp:meta_key><![CDATA[{key}]]></wp:meta_key>
            <wp:meta_value><![CDATA[{value}]]></wp:meta_value>
        </wp:postmeta>
"""

ATTACHMENT_ITEM = """        <item>
          <title>{image_id}</title>
          <link>{upload_root}{folder}{ending}/attachment/{image_id}/</link>
          <pubDate>{pub_date}</pubDate>
          <dc:creator><![CDATA[{author}]]></dc:creator>
          <guid isPermaLink="false">{image_url}</guid>
          <description/>
          <content:encoded><![CDATA[]]></content:encoded>
          <excerpt:encoded><![CDATA[{caption}]]></excerpt:encoded>
          <wp:post_id>{image_id}</wp:post_id>
          <wp:post_date>{post_date}</wp:post_date>
          <wp:post_date_gmt>{post_date}</wp:post_date_gmt>
          <wp:comment_status>closed</wp:comment_status>
          <wp:ping_status>closed</wp:ping_status>
          <wp:post_name></wp:post_name>
          <wp:status>inherit</wp:status>
          <wp:post_parent>{post_id}</wp:post_parent>
          <wp:menu_order>0</wp:menu_order>
          <wp:post_type>attachment</wp:post_type>
          <wp:post_password/>
          <wp:is_sticky>0</wp:is_sticky>
          <wp:attachment_url>{image_url}</wp:attachment_url>
          <wp:postmeta>
              <wp:meta_key><![CDATA[_wp_attached_file]]></wp:meta_key>
              <wp:meta_value><![CDATA[{folder}{file}]]></wp:meta_value>
          </wp:postmeta>
        </item>


"""

CAPTION = (
    '[caption id="attachment_{image_id}" align="alignright" width="{width}"]'
    '<a href="{path}"><img class="size-full wp-image-{image_id}" src="{path}" alt="{caption}"'
    ' width="{width}" height="{height}" /></a>{caption}[/caption]\n'
)

MARKDOWN = """---
layout: post
title: "{title}"
subhead: "{subhead}"
author: {author}
article_author: {article_author}
article_author_role: {role}
article_author_telephone: {telephone}
campus_message:
    - from: "{message_from}"
      to: "{message_to}"
post_id: {post_id}
categories:
{categories}images:
{images}---

{captions}{body}
{permalink}
"""

CATEGORY_LINES = """  - name: {name}
    nicename: {nicename}
"""

MARKDOWN_IMAGE = """  - file: {image_url}
    image_id: {image_id}
    caption: "{caption}"
    permalink: "{upload_root}{folder}{ending}/attachment/{image_id}/"
    _wp_attached_file: "{folder}{file}"
"""

CATEGORISED = """---
{metadata}categories:
{categories}---
{body}"""

TRAINING = """{marker}
{categories}{marker}
{body}
"""

MEDIA_FOLDER = "wp-content/uploads/"
